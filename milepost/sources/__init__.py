"""Reading landed JSON and writing artifacts and flat exports."""
