"""Where changes come from: table snapshots and mutation-log segments."""
