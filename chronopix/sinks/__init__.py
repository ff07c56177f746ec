"""How results are stored: types and sentinels, names, writers, what went in."""
