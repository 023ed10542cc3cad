"""Column expressions (``Column -> Column``)."""
