"""Streams: the table layer has none; tables with a listing function list their files again for every query."""
