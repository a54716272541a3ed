"""The lakehouse jobs themselves, as functions from DataFrames to DataFrames."""
