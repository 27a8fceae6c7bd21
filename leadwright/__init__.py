"""Point-in-time lead features, scorecards and monitoring as PySpark DataFrame operators."""
