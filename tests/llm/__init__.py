"""Tests of the corpus operators; a package, so that its conftest has a name of its own."""
