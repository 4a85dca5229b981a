"""tokenmill: language-model data work as Spark DataFrame operators."""
