"""Column builders (pure Spark SQL expressions, whole-stage-codegen friendly)."""
