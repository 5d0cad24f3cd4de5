"""The session fixture is that of the folder above."""
