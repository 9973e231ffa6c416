"""The arrivals star: its specs, tables, run and analyses."""
