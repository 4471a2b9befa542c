"""DataFrame-to-DataFrame operators over metric series."""
