"""The datasets: cleaned readings, scheduled segments, delay and congestion analyses, the whole workflow."""
