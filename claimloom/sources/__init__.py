"""Where claims come from and where files are kept."""
