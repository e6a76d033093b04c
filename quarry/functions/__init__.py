from quarry.functions.expressions import (
    tenths_celsius_to_fahrenheit, word_tokens, line_tokens_jvm, adjacency_tokens,
    adjacency_neighbour_count, cosine_score, float_lit,
)

__all__ = ["tenths_celsius_to_fahrenheit", "word_tokens", "line_tokens_jvm",
           "adjacency_tokens", "adjacency_neighbour_count", "cosine_score", "float_lit"]
