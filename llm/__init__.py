"""Operators for preparing language-model training data, their registered queries and the pipeline's stages."""
