"""Ratings analytics and top-N recommendation as Spark jobs."""
