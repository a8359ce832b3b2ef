"""Column functions: text, entities, dates, links and HTML regions."""
