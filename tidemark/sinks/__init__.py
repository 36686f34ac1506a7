"""Where results are kept: the two layers, the control tables, the messages."""
