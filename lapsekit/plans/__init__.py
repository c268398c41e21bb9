"""Composing operators into whole runs, and deciding plans by measured size."""
