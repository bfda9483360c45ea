"""Clinical data harmonisation on Spark: landing, mapping, modelling, de-identification and checks."""
