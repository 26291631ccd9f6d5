"""Result tables: which old rows a new slice replaces, and how the outcome is written."""
