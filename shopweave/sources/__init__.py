"""Reading landed dumps and files, and keeping tables."""
