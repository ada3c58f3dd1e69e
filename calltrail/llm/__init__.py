"""Training-data operators on Spark; nothing outside this folder imports them."""
