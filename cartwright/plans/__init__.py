"""The warehouse: staging loads, dimensions, facts, views, dashboard cards."""
