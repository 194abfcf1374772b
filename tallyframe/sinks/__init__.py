"""Writers of text, delimited and CSV output."""
