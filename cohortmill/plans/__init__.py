"""Compositions of the operators into whole runs."""
