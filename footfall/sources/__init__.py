"""Tables in and out: declared schemas, fixed literals, write modes."""
