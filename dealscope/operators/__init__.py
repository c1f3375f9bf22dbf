"""The analytics: pure functions from DataFrame to DataFrame."""
