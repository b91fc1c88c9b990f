"""Result tables composed from operators."""
