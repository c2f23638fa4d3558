"""Reading and writing tables and directories of files."""
