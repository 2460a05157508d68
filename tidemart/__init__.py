"""Detail-level retail warehouse layers built from change and behaviour logs."""
