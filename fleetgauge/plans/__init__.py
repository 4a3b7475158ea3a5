"""The tables of the fleet model, as DataFrame to DataFrame functions."""
