"""Where data comes from: catalogue, business tables, text files, cell tables."""
