"""Marketplace reporting as composable PySpark DataFrame functions."""
