"""Where messages, requests and models come from and go to."""
