"""End-to-end preparation plans composed from the operators."""
