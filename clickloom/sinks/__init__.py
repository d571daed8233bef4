"""Result tables."""
