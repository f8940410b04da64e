"""Reading meter and weather data, and writing results."""
