"""PySpark-native engine for multi-seller product-offer integration."""
