"""Jobs that chain several operators over one shared scan."""
