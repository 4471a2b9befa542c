"""Plan shapes that keep one hot series, value or instant from landing in one task."""
