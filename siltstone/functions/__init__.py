"""Types, casts and the JSON form of maps."""
