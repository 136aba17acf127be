"""No streaming operators: the library's inputs are finite catalogues and rasters."""
