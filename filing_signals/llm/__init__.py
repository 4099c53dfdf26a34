"""Operators of a training-data pipeline over `documents` and `pages`; nothing else imports these."""
