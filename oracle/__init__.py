"""The queries once more in plain SQL, used only to check the Spark results."""
