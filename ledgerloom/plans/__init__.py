"""Marts, and the registry that builds and stores them in dependency order."""
