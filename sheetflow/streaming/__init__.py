"""Following an input folder."""
