"""DataFrame operators. Column names are arguments; nothing here knows the marketing domain."""
