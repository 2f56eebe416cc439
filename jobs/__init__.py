"""Thin mains: arguments in, one library call, one report line out."""
