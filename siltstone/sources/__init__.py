"""Reading and writing: document tables, versioned datasets, file maintenance."""
