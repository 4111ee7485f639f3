"""Reading facts and keeping results."""
