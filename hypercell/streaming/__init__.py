"""Tables fed by streams."""
