from hybrid_sampling.cli import main

main()
