"""Query catalogues: (spark, folder) -> DataFrame, with the equivalent SQL where SQL can express it."""
