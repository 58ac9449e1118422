"""Raw, conformed and reporting plans as DataFrame-to-DataFrame functions."""
