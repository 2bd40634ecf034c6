"""Where messages and tables come from and go to."""
