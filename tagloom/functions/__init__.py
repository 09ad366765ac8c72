"""Column-level rules: time parts, user tags, device names, text rows and age-bucket scores."""
