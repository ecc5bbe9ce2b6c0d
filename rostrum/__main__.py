from rostrum.cli import main

main()
