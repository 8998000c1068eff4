"""Training-data operators: the ten of the list, one module each; nothing else imports this subpackage."""
