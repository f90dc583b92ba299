"""Column builders shared by batch and streaming plans; all run inside codegen."""
