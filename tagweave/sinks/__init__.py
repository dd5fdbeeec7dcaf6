"""Where results go: sorted cell tables and the profile."""
