"""Text and corpus operators that large training-data pipelines need, on the catalogue's own records where it has them."""
