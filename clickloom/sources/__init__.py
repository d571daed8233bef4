"""Tables, dimensions and feeds that the analyses read."""
