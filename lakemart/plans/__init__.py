"""Table specifications and the Bronze, Silver and Gold jobs."""
