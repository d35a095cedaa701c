"""Operators for preparing training text: one module each, nothing else imports them."""
