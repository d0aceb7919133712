"""DataFrame operators (``DataFrame -> DataFrame``), grouped by theme."""
