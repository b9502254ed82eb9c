"""Tables, files and web pages as DataFrames, and the matching sinks."""
