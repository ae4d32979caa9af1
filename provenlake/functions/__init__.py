"""Column functions: canonical JSON, content ids, nested canonical forms, decoders."""
