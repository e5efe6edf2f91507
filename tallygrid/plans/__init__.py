"""Star-schema model, metric objects and their evaluation."""
