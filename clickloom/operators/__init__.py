"""The analyses as DataFrame-to-DataFrame functions."""
