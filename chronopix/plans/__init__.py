"""From a configuration to a plan: validation, epochs, jobs."""
