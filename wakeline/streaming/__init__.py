"""Running the operators on unbounded inputs: sinks, checkpoints, stateful processing."""
