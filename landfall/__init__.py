"""Star-schema lake builder for travel arrivals, city climate and city population."""
