"""The endless form of the dataflow."""
