"""Table operators (``DataFrame -> DataFrame``)."""
