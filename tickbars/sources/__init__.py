"""Where ticks, messages and facts come from."""
