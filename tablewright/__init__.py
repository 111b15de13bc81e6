"""tablewright: data-pipeline operators as DataFrame programs."""
