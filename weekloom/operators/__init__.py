"""``DataFrame -> DataFrame`` steps."""
