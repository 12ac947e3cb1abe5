"""Project files, runs and commands."""
