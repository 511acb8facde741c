"""Names, normalisation and type inference of landed records."""
