"""Column expressions: times, text, links, arrays, payloads and page extraction."""
