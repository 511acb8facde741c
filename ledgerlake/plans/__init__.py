"""The sales register and the order-to-cash plans."""
