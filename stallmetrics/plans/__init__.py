"""Reports. Every function is lazy: typed frames and an explicit moment in, one DataFrame out."""
