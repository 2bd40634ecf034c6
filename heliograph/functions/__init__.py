"""Column functions: measures, angles, exact decimal text, and the JSON wire format."""
