"""Where events come from: JSON message streams, and the stored activity table."""
