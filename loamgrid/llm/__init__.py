"""Operators for preparing training text at scale; nothing else in loamgrid imports this subpackage."""
