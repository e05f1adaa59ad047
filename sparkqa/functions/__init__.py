"""Column functions: text normalisation, tokenisation and span helpers."""
