"""Column builders: plain expressions that stay inside whole-stage codegen."""
