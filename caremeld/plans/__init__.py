"""The models of each layer, written as DataFrame-to-DataFrame functions."""
