"""Query model, builder, compiler and the translation of the older model."""
