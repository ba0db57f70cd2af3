"""The analytics: DataFrame in, DataFrame out."""
