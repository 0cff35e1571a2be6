"""The user tasks as DataFrame plans, plus the query registry."""
