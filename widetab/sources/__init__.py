"""Sources and sinks: labelled tables, text records, predictions, stage outputs."""
