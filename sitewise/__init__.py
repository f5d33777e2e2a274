"""Spark jobs for restriction-site sequencing data that carries unique molecular identifiers."""
