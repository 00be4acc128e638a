"""tallgrass: a PySpark-native analytics engine for spoken-word archives."""
