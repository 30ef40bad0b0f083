"""Training-data operators: mixing, de-duplication, search, language and
quality models, chat formatting, language-model scoring, packing, token
counts. Nothing else in the library imports this subpackage."""
