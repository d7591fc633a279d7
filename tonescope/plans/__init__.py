"""The four results over a complete (batch) feed."""
