"""Tables that are kept on disk."""
