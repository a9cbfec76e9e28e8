"""Tables on disk: raw responses, the article index and the run log."""
