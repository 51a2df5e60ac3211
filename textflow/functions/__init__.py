"""Column functions: content ids, envelopes, text, small lookup tables."""
