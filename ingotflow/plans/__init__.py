"""The five composite pipelines and their command line."""
