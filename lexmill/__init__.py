"""A PySpark-native engine for term taxonomies and the text data that feeds them."""
