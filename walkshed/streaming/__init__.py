"""Landing pages as they arrive."""
