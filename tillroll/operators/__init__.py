"""DataFrame operators: cleaning, quality, questions, exploration, statistics."""
