"""DataFrame-to-DataFrame operators. None runs an action except the size check of a lookup."""
