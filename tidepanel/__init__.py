"""Daily demand panels on Spark: preparation, point-in-time views, forecasts and scores."""
