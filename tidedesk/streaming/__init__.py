"""The stateless stages over a streaming source."""
